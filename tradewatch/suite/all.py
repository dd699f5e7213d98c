"""Import every query module so the registry is complete."""

from tradewatch.suite import core  # noqa: F401
from tradewatch.suite import detect  # noqa: F401
from tradewatch.suite import identity  # noqa: F401
from tradewatch.suite import chain  # noqa: F401
from tradewatch.suite import forecast  # noqa: F401
from tradewatch.suite import serve  # noqa: F401
from tradewatch.suite import graph  # noqa: F401
from tradewatch.suite import storage  # noqa: F401
from tradewatch.suite import streams  # noqa: F401
