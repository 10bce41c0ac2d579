"""The registered queries, each over whole tables, with an independently written SQL statement where one exists."""

from tabloom.catalog import encoding, evaluation, flows, learning, preparation, profiling, sampling  # noqa: F401
from tabloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
