"""Text, graph and matrix analytics as plain DataFrame functions."""

from textgraph import functions, operators, plans, sources
from textgraph.functions import *  # noqa: F401,F403
from textgraph.operators import *  # noqa: F401,F403
from textgraph.plans import *  # noqa: F401,F403
from textgraph.scratch import TableScope
from textgraph.sources import *  # noqa: F401,F403

__all__ = ["TableScope", *functions.__all__, *operators.__all__, *plans.__all__, *sources.__all__]
