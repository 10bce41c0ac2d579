"""The operators, by theme. Learned ones come as a fit that gathers statistics and an apply that starts no job."""
