"""Column helpers: periods, date rebase, sink casts."""
