"""Import every query module so that all queries are registered."""

from __future__ import annotations

from .q_impute import impute_rows, impute_tier_counts, tier_medians  # noqa: F401
from . import q_features  # noqa: F401,E402
from . import q_profile  # noqa: F401,E402
from . import q_folds  # noqa: F401,E402
from . import q_encode  # noqa: F401,E402
from . import q_metrics  # noqa: F401,E402
from . import q_models  # noqa: F401,E402
from . import q_search  # noqa: F401,E402
from . import q_srcline  # noqa: F401,E402
from . import q_audit  # noqa: F401,E402
from . import q_stream  # noqa: F401,E402
from . import q_text  # noqa: F401,E402
