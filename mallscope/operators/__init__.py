"""Reusable DataFrame operators (batch and, where Spark allows, streaming)."""

from mallscope.operators.actions import (category_action_counts, category_counts_for_users,
                                         category_events, category_levels, category_pivot,
                                         category_session_counts, classify_action, date_filter,
                                         explode_ids, filter_actions, hot_categories,
                                         session_counts_for_users, users_in_age)
from mallscope.operators.ads import (ad_minute_counts, ad_minute_json, blacklist_filter,
                                     blacklist_points, date_area_ad_rollup,
                                     date_area_city_ad_count, minute_counts, top3_ads_by_area,
                                     top3_ads_json,
                                     trailing_minutes, user_ad_daily_counts, with_date)
from mallscope.operators.joins import click_star_join, drop_in, keep_in, materialize
from mallscope.operators.ranking import top_ranked
from mallscope.operators.sequences import (jump_ratio, page_flow_pairs, page_jump_counts, page_view_counts,
                                           session_chunks, session_transitions)
from mallscope.operators.shares import item_counts, top_share_text
