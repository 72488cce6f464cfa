"""The same rules over Structured Streaming inputs."""
