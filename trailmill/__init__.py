"""Shop-behaviour analytics on Spark: sessions, page flows, products per area, ad clicks.

Every public function takes and returns DataFrames (or Columns). Nothing here collects rows to the
driver; reports become tables through :mod:`trailmill.plans` and streams through
:mod:`trailmill.streaming`.
"""

__version__ = "0.1.0"
