"""Scans and sinks: page snapshots, registry responses, site rules, versioned master."""
