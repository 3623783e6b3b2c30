"""One function per published indicator; each returns a trend table."""
