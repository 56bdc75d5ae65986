"""Pure ``Column -> Column`` helpers; nothing here triggers a job."""
