"""tabwright: tabular preparation and classification analytics on Spark.

Every operator takes and returns DataFrames and names its key and ordering columns;
small fitted state (a mean, a cut point, a category code) is the only thing that is ever
brought to the driver, and always behind a size check.
"""

__version__ = "0.1.0"
