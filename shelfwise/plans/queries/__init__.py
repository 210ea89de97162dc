"""Registered queries, by subject."""

from shelfwise.plans.queries import catalog, documents, feeds, files, mart, offers, places, prices, search  # noqa: F401
