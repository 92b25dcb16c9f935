"""Domain tables built from the operators: bronze, silver, gold and the daily refresh."""
