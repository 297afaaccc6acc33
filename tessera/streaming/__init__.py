"""Closed days as a stream: each is audited and published once."""
