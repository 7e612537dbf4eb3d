"""Topic, log, change and table inputs."""
