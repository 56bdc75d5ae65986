"""cctally: contact-centre reporting jobs expressed as Spark DataFrame plans.

Sub-packages
------------
functions   pure ``Column -> Column`` helpers (text, rules, dates)
operators   DataFrame -> DataFrame operators (projection, lookup, dedup, counts)
sources     folder readers (delimited, key=value, dimensions) and sinks
plans       the user-level jobs (accumulated, contact base, consolidation, ...),
            their command line (``python -m cctally <job>``) and the query
            catalogue used by the driver contract
streaming   incremental (availableNow) ingestion of landing folders
"""

__version__ = "0.1.0"
