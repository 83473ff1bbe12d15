"""Registered analyses, one module per domain.  Importing fills
``tidemark.registry.REGISTRY``."""

from . import events, finops, jobs, joins, models, security, slo, stateful, streams, warehouse  # noqa: F401
