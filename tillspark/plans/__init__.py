"""Business reports and composite jobs, built from the operators."""
