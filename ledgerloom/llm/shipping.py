"""The package's way to Python workers, see ``ledgerloom.shipping``."""

from ledgerloom.shipping import BATCH_BYTES, ship

__all__ = ["BATCH_BYTES", "ship"]
