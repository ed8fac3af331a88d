"""Table definitions, the per-table job, registered queries with their oracle SQL, plan explain tool."""
