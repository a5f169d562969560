"""Named marts, presentation queries and their oracle SQL."""
