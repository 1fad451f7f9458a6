from ledgerloom.sources.files import (
    count_rows,
    read_clean,
    read_rates_json,
    read_rejected,
    read_report_csv,
    read_transactions_csv,
)
from ledgerloom.sources.messages import (
    kafka_options,
    read_messages,
    read_message_stream,
    to_messages,
    write_messages,
)

__all__ = [
    "count_rows",
    "kafka_options",
    "read_clean",
    "read_messages",
    "read_message_stream",
    "read_rates_json",
    "read_rejected",
    "read_report_csv",
    "read_transactions_csv",
    "to_messages",
    "write_messages",
]
