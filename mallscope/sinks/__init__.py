from mallscope.sinks.published import (compact_totals, latest_totals, publish, read_newest,
                                       read_published, read_upserted, upsert)
from mallscope.sinks.tables import (jdbc_options, kafka_records, publish_ad_log, replace_table,
                                    write_jdbc)

__all__ = ["upsert", "read_upserted", "publish", "read_published", "read_newest", "latest_totals",
           "compact_totals",
           "write_jdbc", "jdbc_options", "replace_table", "kafka_records", "publish_ad_log"]
