"""DataFrame operators: repair, sessions, dwell time, KPIs, charts, schedule."""
