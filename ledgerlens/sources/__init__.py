from ledgerlens.sources.ledger import (  # noqa: F401
    parse_blocks,
    parse_contracts,
    parse_popular_contracts,
    parse_registry,
    parse_transactions,
    read_blocks,
    read_contracts,
    read_lines,
    read_popular_contracts,
    read_registry,
    read_transactions,
    registry_addresses,
)
from ledgerlens.sources.results import (  # noqa: F401
    read_legacy_nested_pairs,
    read_legacy_pairs,
    read_result,
)
