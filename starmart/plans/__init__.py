"""Composed plans: the star builders, test-table adapters and star queries."""

from starmart.plans.insights import (
    airports_per_city,
    arrivals_by_demographics,
    arrivals_by_month,
    arrivals_by_port,
    arrivals_by_temperature,
)
from starmart.plans.star import (
    build_country_codes,
    build_dim_airports,
    build_dim_demographics,
    build_dim_temperature,
    build_fact,
    build_port_codes,
    build_star,
    clean_immigration,
    explore_fact,
    read_star,
    run_etl,
)
