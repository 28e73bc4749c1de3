"""tessera: network reports, k-means and silhouette, trip features on PySpark.

Every job is a DataFrame plan; only the k centroids of a k-means round ever
reach the driver.

Where things are:

* ``tessera.plans.reports`` -- the eight social-network reports
  (``nationality_people``, ``top_pages``, ``people_per_nationality``,
  ``relationship_degree``, ``access_profile``, ``unvisited_friends``,
  ``latest_access``, ``above_average_degree``) and their middle steps.
* ``tessera.operators.kmeans`` -- ``fit2d`` / ``fit_nd`` (seeds, round limit,
  threshold, early stop, any/all), ``assign2d`` / ``assign_nd``, result tables.
* ``tessera.operators.silhouette`` -- ``silhouette_points`` /
  ``silhouette_mean`` (reference or textbook mode).
* ``tessera.plans.trips`` -- ``trip_features``, ``mean_card_tip``.
* ``tessera.sources`` -- delimited readers/writers, stand-in views over the
  parquet test tables, the seeded point generator.
* ``tessera.cli`` -- ``python -m tessera ...`` on delimited files.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel by value: executors need neither
# this package on their path nor the driver's working directory
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["session", "fixed", "sources", "functions", "operators", "plans", "cli"]
