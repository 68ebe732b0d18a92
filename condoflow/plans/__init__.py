"""The user-facing jobs: imports, monthly statements, reports, notifications."""
