"""The job and the registered queries."""
