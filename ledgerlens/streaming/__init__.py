from ledgerlens.streaming.monthly import (
    latest_epoch,  # noqa: F401
    monthly_stats_stream,
    start_monthly_stats,
    start_monthly_stats_to_files,
    transaction_stream,
)
