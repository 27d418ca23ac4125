"""Daily jobs: operators put together, ending in one partition write."""
