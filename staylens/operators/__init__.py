"""DataFrame -> DataFrame operators: adapters, dimension cleaning,
reservations (dedup, nights), KPI fact and report, data-quality marts and
checks."""
