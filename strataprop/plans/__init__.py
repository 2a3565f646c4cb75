"""End-to-end flows, and the fixture queries that exercise each operator."""
