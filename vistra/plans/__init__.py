"""End-to-end plans: registered queries, oracle SQL, the batch job, the search."""
