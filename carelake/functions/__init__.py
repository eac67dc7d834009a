"""Column-expression functions (no UDFs): coercion, text, dates, labels, names."""

from carelake.functions.coerce import *  # noqa: F401,F403
from carelake.functions.dates import *  # noqa: F401,F403
from carelake.functions.labels import *  # noqa: F401,F403
from carelake.functions.text import *  # noqa: F401,F403
