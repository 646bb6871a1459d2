"""Column expressions (scalar functions) used by the operators."""

from pricelens.functions.exprs import *  # noqa: F401,F403
from pricelens.functions import exprs  # noqa: F401
