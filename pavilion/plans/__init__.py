"""What the operators are composed into: the cleaning, the named analytics and the jobs."""
