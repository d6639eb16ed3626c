"""Column -> Column functions; nothing here triggers an action."""
