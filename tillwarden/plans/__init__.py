"""End-to-end plans: table adapters, the nightly run, registered queries and their SQL."""
