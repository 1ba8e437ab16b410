"""Plan shapes shared by operators, and the composite survey recipes."""
