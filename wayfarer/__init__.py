"""wayfarer: layered trip analytics (raw -> clean -> rollup -> report) as PySpark DataFrame jobs.

Every public function takes DataFrames (and keyword parameters) and returns a lazy DataFrame;
nothing is collected to the driver and no session is created behind the caller's back.
"""

__version__ = "0.1.0"
