"""Synthetic-population engine: census-style targets, seeds, weights, draws and checks as Spark jobs."""

from tractweave.config import Breaks, DrawConfig, FitConfig

__all__ = ["Breaks", "DrawConfig", "FitConfig"]
__version__ = "0.1.0"
