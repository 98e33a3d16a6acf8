"""Jobs: chains of operators a user calls as a whole."""
