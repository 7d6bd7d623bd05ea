from tabmine.functions.derive import (  # noqa: F401
    active_items,
    age_midpoint,
    binary_target,
    change_count,
    icd9_group,
    itemize,
    normalized_id,
    parse_number,
    run_signature,
    stay_bucket,
    strip_ws,
    visit_bucket,
    zscore_band,
)
