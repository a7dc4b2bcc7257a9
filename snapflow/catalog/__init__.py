"""Every operator run on the shared test tables, with the SQL it must agree with."""

from . import batches, learning
from .oracles import ORACLES as SINGLE
from .queries import QUERIES

ORACLES = SINGLE | batches.ORACLES | learning.ORACLES

__all__ = ["ORACLES", "QUERIES"]
