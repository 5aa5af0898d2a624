"""The registered queries: event tables derived from the driver's data, and what to run on them."""
