"""Stop-to-stop travel segments, routes and arrival-time models from vehicle position pings, on Spark."""
