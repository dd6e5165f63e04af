"""All parts of the suite."""

from suite.quality import quality
from suite.reshape import reshape
from suite.sources import sources
from suite.star import star
from suite.streams import streams

ALL = [star, reshape, quality, sources, streams]
