"""farezone: trip analytics on Spark -- monthly trip counts per service zone,
zone volume, fares and driver pay, as DataFrame-to-DataFrame operators."""

__version__ = "0.1.0"
