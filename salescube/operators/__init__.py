"""Building blocks shared by the jobs."""
