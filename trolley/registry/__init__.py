"""The named queries and, where SQL can say it, the SQL each must agree with."""

from trolley.registry.oracles import ORACLES
from trolley.registry.queries import QUERIES, flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
