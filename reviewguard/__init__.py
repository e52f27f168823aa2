"""reviewguard: Spark-native detection of coordinated review abuse.

Every operator is DataFrame -> DataFrame, lazy, and runs on the cluster;
nothing is collected to the driver except bounded scalars.
"""

__version__ = "0.1.0"
