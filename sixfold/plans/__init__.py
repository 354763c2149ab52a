"""The warehouse load, its seven views, and the queries registered for the driver."""
