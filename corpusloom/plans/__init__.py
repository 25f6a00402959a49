"""Ways to lay out work: ordered passes that survive hot keys, sized lookups, and whole chains."""
