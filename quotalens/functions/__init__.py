"""Column expressions (pure, JVM-side built-ins)."""
from quotalens.functions.exprs import *  # noqa: F401,F403
