"""Column expressions and the ad-line text format."""

from mallscope.functions.adlog import parse_ad_log, render_ad_log
from mallscope.functions.scalars import (double_text, epoch_ms_to_date,
                                         epoch_ms_to_minute, epoch_ms_to_timestamp,
                                         half_up_tenth, kv_key, minute_to_hhmm, ntz_epoch_ms,
                                         pairs_to_json, percent_tenth, split_ids, with_task_id)
