"""Query catalogue, oracle SQL and plan inspection."""
