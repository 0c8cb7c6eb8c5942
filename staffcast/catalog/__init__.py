"""Registered queries and their SQL; importing the package registers all of them."""

from staffcast.catalog import fitted as fitted, queries as queries
