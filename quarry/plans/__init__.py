"""Registered queries over the provided tables (imported for side effects)."""

from . import registry  # noqa: F401
from . import q_core  # noqa: F401
from . import q_functions  # noqa: F401
from . import q_relational  # noqa: F401
from . import q_text  # noqa: F401
from . import q_evidence  # noqa: F401
from . import q_sources  # noqa: F401
from . import q_decisions  # noqa: F401
from . import q_scale  # noqa: F401
from .registry import REGISTRY  # noqa: F401
