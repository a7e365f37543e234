"""Table loading, the logical tables of the model, stream sources and job conditions."""

from mallscope.sources.conditions import load_conditions, parse_conditions
from mallscope.sources.streams import (kafka_options, offset_ranges, read_ad_stream,
                                       read_offsets, record_offsets)
from mallscope.sources.tables import SCHEMAS, conform, load_table
