"""Writers of tables and reports. Reports are for people: what they show is bounded and checked."""
