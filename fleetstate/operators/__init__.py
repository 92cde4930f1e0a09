"""The building blocks of the marts: staging, outage islands, rollups, keyed dedupe."""
