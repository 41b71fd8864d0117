from rowlog.sources.raw import assert_event_types, closed_files, raw_events, read_changes
