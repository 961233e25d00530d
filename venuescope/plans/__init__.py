"""Named query catalogue, oracle SQL and the end-to-end job."""
