"""Readers: raw PMS feeds (text only), typed seeds, and the projection of the
driver's benchmark tables onto the raw feed shapes."""

from staylens.sources.feeds import (  # noqa: F401
    empty_feed, load_all, load_raw, read_cloud, read_native, read_nordic,
)
from staylens.sources.seeds import read_inventory, read_manifest, read_market, read_seed  # noqa: F401
