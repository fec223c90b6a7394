"""The composed datasets: conformed tables, marts, views and charts."""
