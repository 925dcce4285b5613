"""Operators of a training-data pipeline, each by its own method; nothing else imports them."""
