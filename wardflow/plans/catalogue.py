"""Imports every query module so that its queries are registered."""

from . import cohort_queries  # noqa: F401
from . import label_queries  # noqa: F401
from . import feature_queries  # noqa: F401
from . import timeline_queries  # noqa: F401
from . import labeler_queries  # noqa: F401
from . import timeline_feature_queries  # noqa: F401
from . import sepsis_queries  # noqa: F401
from . import split_queries  # noqa: F401
from . import evaluation_queries  # noqa: F401
from . import source_queries  # noqa: F401
