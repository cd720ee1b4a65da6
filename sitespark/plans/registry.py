"""All registered queries of the analytics engine and their SQL."""

from . import catalogue, rasters, scoring, shapes, sites  # noqa: F401  each adds its queries to those of sites

QUERIES, SQL = sites.QUERIES, sites.SQL
