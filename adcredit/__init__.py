"""adcredit — marketing attribution and campaign analytics on Spark.

Every public operator is ``DataFrame -> DataFrame`` (lazy); nothing is
collected to the driver except API-sized final results.
"""

from adcredit.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
