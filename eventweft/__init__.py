"""eventweft: nested business events in, clean linked relational tables out, on Spark."""

from eventweft.spec import Column, Entity, ForeignKey, Link, Model, Reject, Source

__all__ = ["Column", "Entity", "ForeignKey", "Link", "Model", "Reject", "Source"]
