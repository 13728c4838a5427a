"""Plans: the customer metrics, the profiles built from them, and the batch job."""
