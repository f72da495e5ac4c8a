from tidewatch.sources.fixtures import load_table, tx, tx_from  # noqa: F401
from tidewatch.sources.raw import read_raw, refresh_raw, register_raw, write_raw  # noqa: F401
