"""shapekit — Spark jobs for turning free text into structured JSON records.

The package covers the data work around text-to-JSON extraction with language
models: reading loosely formed sources, pairing structured rows with their
free-text versions, validating and repairing raw model outputs, building
training examples, batch scoring with a user-supplied function, and quality
reports and audits.  Everything is expressed with the DataFrame API so that
Catalyst plans it and the work spreads over the cluster.
"""

from shapekit.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
