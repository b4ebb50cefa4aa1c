"""Session settings and plan inspection."""
