import numpy as np
import pytest

from tidemark.llm import webp

RNG = np.random.default_rng(7)


def photo(h, w):
    y, x = np.mgrid[:h, :w]
    noise = RNG.integers(0, 6, (h, w))
    return webp._merge(np.full((h, w), 255), (3 * x + noise) & 255, (2 * y + x) & 255, (x * y // 3 + noise) & 255)


def few(h, w, n):
    colors = RNG.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    return colors[RNG.integers(0, n, (h, w))]


@pytest.mark.parametrize("shape", [(1, 1), (1, 9), (7, 1), (13, 21), (33, 17)])
@pytest.mark.parametrize("cache", [0, 1, 6, 11])
@pytest.mark.parametrize("refs", [False, True])
def test_literals_references_cache(shape, cache, refs):
    for image in (photo(*shape), few(*shape, 5), np.zeros(shape, np.uint32)):
        assert (webp.decode(webp.encode(image, cache_bits=cache, references=refs)) == image).all()


@pytest.mark.parametrize("cache", [0, 3, 9])
@pytest.mark.parametrize("refs", [False, True])
def test_one_group_equals_pixel_by_pixel(monkeypatch, cache, refs):
    images = [photo(40, 61), few(70, 33, 9), few(64, 64, 200), np.repeat(photo(30, 20), 3, axis=1), few(50, 50, 2) | np.uint32(0xFF00FF00)]
    files = [webp.encode(x, cache_bits=cache, references=refs, green=g) for x in images for g in (False, True)]
    fast = [webp.decode(f) for f in files]
    monkeypatch.setattr(webp, "_one_group", lambda *a: None)
    monkeypatch.setattr(webp, "STRETCH", 64)
    assert all((a == webp.decode(f)).all() for a, f in zip(fast, files, strict=True))
    assert all((a == x).all() for a, x in zip(fast[::2], images, strict=True))


@pytest.mark.parametrize("mode", range(14))
def test_predictors(mode):
    image = few(11, 14, 200)
    modes = np.full((3, 4), mode << 8, np.uint32)
    assert (webp.decode(webp.encode(image, modes=modes)) == image).all()


def test_all_transforms_together():
    image = photo(19, 23)
    modes = RNG.integers(0, 14, (5, 6), dtype=np.uint32) << 8
    elements = RNG.integers(0, 1 << 24, (5, 6), dtype=np.uint32) | 0xFF000000
    for cache in (0, 4):
        data = webp.encode(image, modes=modes, elements=elements.astype(np.uint32), green=True, cache_bits=cache, group_block=3)
        assert (webp.decode(data) == image).all()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 100, 256])
def test_palettes(n):
    for shape in ((6, 13), (20, 16)):
        image = few(*shape, n)
        assert (webp.decode(webp.encode(image, palette=True)) == image).all()


@pytest.mark.parametrize("n", [1, 2, 4, 9, 16, 17, 33, 90, 128, 129, 256])
def test_samples(n):
    values = RNG.permutation(256)[:n].astype(np.uint8)
    for shape in ((1, 192), (3, 8), (40, 192)):
        samples = values[RNG.integers(0, n, shape)]
        assert (webp.samples_of(webp.decode(webp.encode_grey(samples))) == samples).all()


# The format's map of short distances (RFC 9649, section 5.2.2).
DISTANCES = """
0,1 1,0 1,1 -1,1 0,2 2,0 1,2 -1,2 2,1 -2,1 2,2 -2,2 0,3 3,0 1,3 -1,3 3,1 -3,1 2,3 -2,3 3,2 -3,2 0,4 4,0
1,4 -1,4 4,1 -4,1 3,3 -3,3 2,4 -2,4 4,2 -4,2 0,5 3,4 -3,4 4,3 -4,3 5,0 1,5 -1,5 5,1 -5,1 2,5 -2,5 5,2 -5,2
4,4 -4,4 3,5 -3,5 5,3 -5,3 0,6 6,0 1,6 -1,6 6,1 -6,1 2,6 -2,6 6,2 -6,2 4,5 -4,5 5,4 -5,4 3,6 -3,6 6,3 -6,3
0,7 7,0 1,7 -1,7 5,5 -5,5 7,1 -7,1 4,6 -4,6 6,4 -6,4 2,7 -2,7 7,2 -7,2 3,7 -3,7 7,3 -7,3 5,6 -5,6 6,5 -6,5
8,0 4,7 -4,7 7,4 -7,4 8,1 8,2 6,6 -6,6 8,3 5,7 -5,7 7,5 -7,5 8,4 6,7 -6,7 7,6 -7,6 8,5 7,7 -7,7 8,6 8,7
"""


def test_short_distances_are_the_format_s():
    assert webp.NEAR == [tuple(map(int, p.split(","))) for p in DISTANCES.split()]


def test_the_predictor_rule_by_hand():
    left, top, corner = 0xFF102030, 0xFF405060, 0xFF302010
    assert webp._predict(12, left, top, 0, corner) == 0xFF205080
    assert webp._predict(7, left, top, 0, corner) == 0xFF283848
    assert webp._predict(13, 0xFF000000, 0xFF000000, 0, 0xFF010101) == 0xFF000000  # halves toward zero
    assert webp.NEAR[:8] == [(0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2)]
    assert len(webp.NEAR) == 120


def test_damage_is_an_error():
    good = webp.encode(photo(9, 9))
    for bad in (b"", b"RIFF", good[:20], good[:40], b"JUNK" + good[4:]):
        with pytest.raises(webp.WebPError):
            webp.decode(bad)


def test_grey_samples_by_the_named_method(monkeypatch):
    from tidemark.llm import media

    text = b"the quick brown fox jumps over the lazy dog, again and again; " * 40
    words = b" ".join(RNG.choice([b"alpha", b"beta", b"gamma", b"delta", b"epsilon"], 900).tolist())
    smooth = (np.cumsum(RNG.integers(-1, 2, 192 * 30)) & 255).astype(np.uint8)
    runs = np.repeat(RNG.integers(0, 256, 3000), RNG.integers(1, 5, 3000)).astype(np.uint8)
    noise = RNG.integers(0, 256, 192 * 600).astype(np.uint8)
    seen = []
    for data in (b"", b"a", text, words, smooth.tobytes(), runs.tobytes(), noise.tobytes(), b"ab" * 5000, bytes(192), bytes(20_000)):
        payload = data + b" " * (-len(data) % 192 or 192 * (not data))
        stored = media.store(payload)
        assert media.load(stored).tobytes() == payload
        seen.append(len(stored) / len(payload))
    assert seen[2] < 0.1 and seen[3] < 0.45 and seen[4] < 0.4
    for shape in ((1, 1), (1, 5), (7, 1), (3, 9), (600, 7)):
        samples = RNG.integers(0, 20, shape).astype(np.uint8)
        assert (webp.samples_of(webp.decode(webp.encode_grey(samples))) == samples).all()
    far = np.concatenate([noise[:1920], RNG.integers(0, 256, 192 * 5600).astype(np.uint8), noise[:1920]])  # beyond the format's distances
    assert media.load(media.store(far.tobytes())).tobytes() == far.tobytes()
    # codes of several lengths and copies are what a text is read by
    codes, plain = [], webp._one_group

    def spied(bits, group, *rest):
        codes.append(dict(zip(group[0].symbols.tolist(), group[0].sizes.tolist(), strict=True)))
        return plain(bits, group, *rest)

    monkeypatch.setattr(webp, "_one_group", spied)
    media.load(media.store(media.payload_of(words.decode())[0]))
    assert len(set(codes[0].values())) > 1 and any(256 <= s < 280 for s in codes[0])


def test_each_transform_is_chosen_where_it_pays(monkeypatch):
    from tidemark.llm import media

    ran = set()
    for name in ("_unpredict", "_unbundle", "_add_green", "_with_cache", "_one_group"):
        plain = getattr(webp, name)
        monkeypatch.setattr(webp, name, lambda *a, plain=plain, name=name: ran.add(name) or plain(*a))
    ramp = (np.cumsum(RNG.integers(0, 3, 192 * 40)) & 255).astype(np.uint8)
    two = np.array([[0, 1, 1, 0, 1, 0, 0, 0], [1, 1, 0, 1, 0, 0, 1, 1], [0, 0, 0, 1, 0, 1, 1, 1]], np.uint8)[RNG.integers(0, 3, 480)] * 100
    pairs = RNG.integers(32, 232, (1440, 2)).astype(np.uint8)
    pairs = pairs[:, [0, 0, 1, 1, 0, 0, 1, 1]].ravel()  # a colour seen just before comes again, not the difference to it
    for payload in (ramp.tobytes(), two.tobytes(), pairs.tobytes()):
        stored = media.store(payload)
        assert media.load(stored).tobytes() == payload and len(stored) < 0.8 * len(payload)
    assert ran == {"_unpredict", "_unbundle", "_add_green", "_with_cache", "_one_group"}


class Bits:
    """A stream written by hand: (value, bits) pairs lowest bit first, and codes as they stand."""

    def __init__(self):
        self.text = ""

    def put(self, *pairs):
        for p in pairs:
            self.text += p if isinstance(p, str) else format(p[0], f"0{p[1]}b")[::-1]
        return self

    def file(self):
        text = self.text + "0" * (-len(self.text) % 8)
        body = bytes(int(text[k : k + 8][::-1], 2) for k in range(0, len(text), 8))
        chunk = b"VP8L" + len(body).to_bytes(4, "little") + body + b"\0" * (len(body) % 2)
        return b"RIFF" + (len(chunk) + 4).to_bytes(4, "little") + b"WEBP" + chunk


def one(symbol):  # a simple code of one symbol, eight bits wide
    return [(1, 1), (0, 1), (1, 1), (symbol, 8)]


def two(a, b):  # a simple code of two symbols: a is bit 0, b is bit 1
    return [(1, 1), (1, 1), (1, 1), (a, 8), (b, 8)]


def head(width, height):
    return Bits().put((0x2F, 8), (width - 1, 14), (height - 1, 14), (0, 1), (0, 3))


def test_a_file_by_hand_literals():
    bits = head(3, 1).put((0, 1))  # no transform
    bits.put((0, 1), (0, 1))  # no cache, one group
    bits.put(*two(10, 200), *one(7), *two(1, 2), *one(255), *one(0))
    bits.put("10" "01" "11")  # (green, blue) of each pixel
    assert webp.decode(bits.file()).tolist() == [[0xFF07C801, 0xFF070A02, 0xFF07C802]]


def test_a_file_by_hand_palette():
    # two colours, eight indices to a byte: 0b101 is colours 1, 0, 1
    bits = head(3, 1).put((1, 1), (webp.PALETTE, 2), (1, 8))
    bits.put((0, 1), *one(0), *two(5, 9), *one(0), *two(0, 255), *one(0))  # no cache; deltas of (red, alpha)
    bits.put("01" "10")  # 0xFF050000, then 0x00090000 more
    bits.put((0, 1), (0, 1), (0, 1), *one(5), *one(0), *one(0), *one(0), *one(0))
    assert webp.decode(bits.file()).tolist() == [[0xFF0E0000, 0xFF050000, 0xFF0E0000]]


def test_a_file_by_hand_green():
    # green 3 comes back to red (1) and blue (254)
    bits = head(1, 1).put((1, 1), (webp.GREEN, 2), (0, 1), (0, 1), (0, 1), *one(3), *one(1), *one(254), *one(255), *one(0))
    assert webp.decode(bits.file()).tolist() == [[0xFF040301]]


def test_a_file_by_hand_predictor():
    # mode 2 (above) in one block of four: the first row adds to the left, the second to what stands above
    bits = head(2, 2).put((1, 1), (webp.PREDICTOR, 2), (0, 3))
    bits.put((0, 1), *one(2), *one(0), *one(0), *one(255), *one(0), (0, 1))
    bits.put((0, 1), (0, 1), *two(1, 4), *one(0), *one(0), *one(0), *one(0), "0110")
    assert webp.decode(bits.file()).tolist() == [[0xFF000100, 0xFF000500], [0xFF000500, 0xFF000600]]


def test_a_file_by_hand_cross_colour():
    # green 8: red gains (16 * 8) >> 5 = 4, blue (-32 * 8) >> 5 = -8 and (32 * 5) >> 5 = 5 for the new red
    bits = head(1, 1).put((1, 1), (webp.CROSS, 2), (0, 3))
    bits.put((0, 1), *one(256 - 32), *one(32), *one(16), *one(255), *one(0), (0, 1))
    bits.put((0, 1), (0, 1), *one(8), *one(1), *one(10), *one(255), *one(0))
    assert webp.decode(bits.file()).tolist() == [[0xFF050807]]


@pytest.mark.parametrize("green", [8, 9])
def test_a_file_by_hand_copies_and_cache(green):
    # green codes: 0 is 0, ``green`` is 10, 258 (a copy of three) is 110, 281 (cache entry 1) is 111
    bits = head(9, 1).put((0, 1), (1, 1), (1, 4), (0, 1))  # a cache of two colours, one group
    # the code for code lengths: 1, 2 and 3 have two bits, short (17) and long (18) runs of zeros three
    bits.put((0, 1), (2, 4), (3, 3), (3, 3), (0, 3), (2, 3), (2, 3), (2, 3), (0, 1))
    bits.put("00", "110", (green - 4, 3), "01", "111", (127, 7), "111", (108 - green, 7), "10", "111", (11, 7), "10")
    bits.put(*one(0), *one(0), *one(255), *one(1))  # distance prefix 1: near code 2, the pixel before
    bits.put("0", "10", "110", "0", "111", "10", "10")  # black, green, a copy, black, by the cache, green, green
    black, lit = 0xFF000000, 0xFF000000 | green << 8
    cached = lit if green == 8 else 0  # 8 falls to entry 1; 9 falls to entry 0, and entry 1 is as it began
    assert webp.decode(bits.file()).tolist() == [[black, lit, lit, lit, lit, black, cached | black, lit, lit]]
