"""What is computed: marts, their build, reports, audits, data-quality checks."""
