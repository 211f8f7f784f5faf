"""Imports every query module so that each registers its queries."""

from pricelake.plans import q_merge  # noqa: F401
from pricelake.plans import q_text  # noqa: F401
from pricelake.plans import q_urls  # noqa: F401
from pricelake.plans import q_land  # noqa: F401
from pricelake.plans import q_payload  # noqa: F401
from pricelake.plans import q_cards  # noqa: F401
from pricelake.plans import q_stream  # noqa: F401
from pricelake.plans import q_daily  # noqa: F401
from pricelake.plans import q_discovery  # noqa: F401
from pricelake.plans import q_more  # noqa: F401
