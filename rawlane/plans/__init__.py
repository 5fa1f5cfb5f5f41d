"""End-to-end plans: intake, and the analytical queries over what it loads."""
