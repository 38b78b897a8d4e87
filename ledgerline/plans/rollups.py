"""Tables that many queries read, written once per application below the shared folder.

``shared`` has the staged and order-level tables the facts are built from, so that every feed is read once; ``itemised``
has the order items as well, which are larger than all others together and which few queries ask for. ``rolled`` has daily
sums of all facts on top, so that metrics of any period, running totals and comparisons read one row per day, fact,
channel and warehouse instead of the facts.
"""

from __future__ import annotations

from collections.abc import Callable

from ledgerline.session import folder_exists, shared_folder

ITEMS = ("clean_order_items",)
SHARED = ("stg_orders", "stg_refunds", "stg_payments", "int_order_revenue")
# Daily sums are made of the days of stock, among others.
ROLLED = ("dim_customer", "stock_days", "daily_sums")

# The warehouse that reads the tables and the folders they are in, its base's among them.
_kept: dict[tuple, tuple] = {}


def _there(warehouse, purpose: str) -> bool:
    kept = _kept.get((warehouse, purpose))
    return kept is not None and all(folder_exists(warehouse.spark, folder) for folder in kept[1])


def _written(warehouse, purpose: str, names: tuple[str, ...], base: Callable):
    """A copy of ``base(warehouse)`` that reads ``names`` from files; written again when those are gone."""
    if not _there(warehouse, purpose):
        below = base(warehouse)
        folders = next((folders for made, folders in _kept.values() if made is below), ())
        made, folder = below.copy(), shared_folder(warehouse.spark, purpose)
        made.materialise(names, folder)
        _kept[warehouse, purpose] = made, (*folders, folder)
    return _kept[warehouse, purpose][0]


def _itself(warehouse):
    return warehouse


def shared(warehouse):
    """The warehouse with its staged and order-level tables read from files."""
    if not _there(warehouse, "shared") and _there(warehouse, "itemised"):
        return itemised(warehouse)
    return _written(warehouse, "shared", SHARED, _itself)


def itemised(warehouse):
    """The same with the order items; orders are built from the written items unless they are there already."""
    if _there(warehouse, "shared"):
        return _written(warehouse, "itemised", ITEMS, shared)
    return _written(warehouse, "itemised", (*ITEMS, *SHARED), _itself)


def rolled(warehouse):
    """The warehouse with daily sums, days of stock and customers read from files."""
    return _written(warehouse, "rollups", ROLLED, shared)


def over(tables: Callable, model: Callable) -> Callable:
    """A registered query that runs ``model`` on written tables."""
    return lambda warehouse: tables(warehouse).run(model)
