"""DataFrame -> DataFrame operators: claims, messages, surveys, sessions, dashboard, merge, ranking."""
