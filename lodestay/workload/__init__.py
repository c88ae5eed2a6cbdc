"""Registered queries over the star schema; importing this package registers all of them."""

from . import building, cleaning, jobs, modelling, pricing  # noqa: F401
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
