"""End-to-end plans: validate an accession, plan a campaign, report on one."""
