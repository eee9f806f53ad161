"""Query plans: the query catalog, archived variants, registry for the driver."""
