"""Operators run on the driver's tables, each with its check SQL."""

from . import cost, evaluation, inputs, prediction, splitting, theming
from .base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "cost", "evaluation", "inputs", "prediction", "splitting", "theming"]
