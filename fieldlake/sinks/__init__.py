"""Writers: settled intermediate tables, published snapshots, databases, small logs."""
