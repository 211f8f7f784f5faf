"""Category-target operators: labels, limits and the targets document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.functions import constants as K
from pricelake.functions.text import _col, title_case


def group_label(slug) -> Column:
    """The fixed label of a group slug, else the title-cased slug."""
    pairs = [x for kv in K.ALCAMPO_GROUP_LABELS.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]
    labels = F.create_map(*pairs)
    s = _col(slug)
    return F.coalesce(F.try_element_at(labels, s), title_case(F.replace(s, F.lit("-"), F.lit(" "))))
