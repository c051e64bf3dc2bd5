"""All registered queries; importing the groups fills the registry."""

from creditloom.queries import arrivals, columns, files, flows, incremental, marts, parity, publishing, synthetic
from creditloom.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "arrivals", "columns", "files", "flows", "incremental", "marts", "parity", "publishing", "synthetic"]
