"""Fitted cleaning steps applied to streaming frames (the reference has no streaming)."""
