"""Queries over the driver's tables, one or more per operator, each with its SQL counterpart."""
