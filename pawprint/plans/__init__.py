"""Plans: registered queries, oracle SQL, search and job plans."""
