"""Credit-union reporting layer computed directly on Spark DataFrames."""

from ledgerline.params import FIXTURE_PARAMS, Params
from ledgerline.sources.tables import Tables

__all__ = ["Params", "FIXTURE_PARAMS", "Tables"]
