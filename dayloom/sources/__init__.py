"""Landing zone, payloads and dimensions."""
