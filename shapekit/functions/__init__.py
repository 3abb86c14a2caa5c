"""Column-level functions: every one returns a ``Column`` built from Spark
built-ins, so it runs inside whole-stage code generation."""

from shapekit.functions.text import (  # noqa: F401
    strip_ws, strip_fences, first_json_block, with_json_block, outer_brace_slice, normalise_title,
    format_flags,
)
from shapekit.functions.jsonx import (  # noqa: F401
    strict_output, with_lenient_fields, with_api_fields, key_diff, coerce_list,
)
from shapekit.functions.arrays import pad_truncate, attention_mask, mask_prefix, token_budget  # noqa: F401
