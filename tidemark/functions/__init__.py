"""Column expressions (native Spark, no UDFs) shared by the operators."""

from tidemark.functions.columns import *  # noqa: F401,F403
from tidemark.functions.text import *  # noqa: F401,F403
