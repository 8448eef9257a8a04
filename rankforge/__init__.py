"""rankforge: recommendation and hybrid-retrieval analytics as Spark DataFrame operators.

Every public operator takes DataFrames plus plain parameters and returns a
DataFrame. Nothing collects a data-sized table to the driver; the only driver
round trips are one-row scalars (a maximum timestamp, a catalogue size).
"""

__version__ = "0.1.0"
