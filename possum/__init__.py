"""Point-of-sale and client-account analytics as Spark DataFrame jobs.

Every public function takes and returns ``pyspark.sql.DataFrame`` (or
``Column``); nothing is collected to the driver.  See README.md for the
map from the job's relations to the functions here.
"""

__all__ = ["constants", "params", "schemas"]
