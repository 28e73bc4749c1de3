"""Fixed values.

These must equal the values the original jobs use, or results differ.  They
are stated here once, in the order the jobs use them, and imported elsewhere.
"""

# Fixed values -- social reports
NATIONALITY = "United States of America"   # report A filter
TOP_PAGES = 10                             # report B limit
LATEST_ACCESS_MIN = 870400                 # report G: latest access >= this

# Fixed values -- k-means and silhouette
COORD_MIN, COORD_MAX = 0, 10000            # generated 2-D coordinates, both included
GENERATED_POINTS = 5000                    # size of the generated point file
THRESHOLD_2D = 0.5                         # 2-D convergence distance
THRESHOLD_ND = 0.01                        # N-D convergence distance
ROUNDS_ND = 20                             # N-D round limit
STEP_K = 10                                # single step
FIXED_K, FIXED_R = 15, 30                  # fixed rounds
CONV_K, CONV_R = 20, 50                    # early stop
PARTIAL_K, PARTIAL_R = 10, 90              # early stop with partial sums
ASSIGN_K, ASSIGN_R = 20, 50                # final assignment
SILHOUETTE_K = 10                          # clustering scored by the silhouette
SWEEP_K = (5, 10, 15, 20)                  # k values run
SWEEP_R = (10, 20, 30, 50, 90)             # round limits run
MEAN_FORMAT = "%.4f"                       # printed mean silhouette

# Fixed values -- trip features
LIGHT_HOUR_START = 7                       # 07:00 becomes hour 0; earlier hours add 17
CARD_PAYMENT, CASH_PAYMENT = 1, 2          # payment_type codes
NONZERO_COLUMNS = ["pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
                   "total_amount", "passenger_count", "trip_distance"]
DROPPED_COLUMNS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "RatecodeID", "VendorID",
                   "store_and_fwd_flag", "mta_tax", "tip_amount", "improvement_surcharge", "extra",
                   "fare_amount", "pickup_dt", "dropoff_dt", "hour"]
