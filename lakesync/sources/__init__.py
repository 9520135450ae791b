"""Reading landed payloads and documents."""
