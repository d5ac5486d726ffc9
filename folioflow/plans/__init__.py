"""Whole workflows, composed of operators; each has the failure policy of its desk."""
