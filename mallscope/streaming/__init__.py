"""Structured Streaming: query start and state, the blacklist, running totals, the trend, the ad dashboard."""

from mallscope.streaming.blacklist import batch_block_points, counter_totals, passes, unblocked
from mallscope.streaming.queries import DEFAULT_TRIGGER, read_state, start_query, start_stateful, state_info
