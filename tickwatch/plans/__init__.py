"""Composed plans: transform, reports, jobs, registered check queries."""
