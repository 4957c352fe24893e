"""citytherm: entity x time observation analytics on Spark DataFrames.

Every operator takes DataFrames and column names and returns a lazy
DataFrame built from built-in Spark expressions; nothing is collected to
the driver except bounded metadata (a row count used to size a broadcast,
fitted model parameters).
"""

from citytherm.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
