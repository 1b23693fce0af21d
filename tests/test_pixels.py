"""Degradation stages on small images whose results are worked out by hand."""

import math

import numpy as np
import pytest

from scriptorium.operators import images as I
from scriptorium.operators import render as V

RNG = lambda: np.random.Generator(np.random.PCG64(1))


def grey(rows):
    return np.repeat(np.array(rows, np.uint8)[..., None], 3, axis=2)


def plane(image):
    assert (image[..., 0] == image[..., 1]).all() and (image[..., 1] == image[..., 2]).all()
    return image[..., 0].tolist()


def stage(kind, image, **options):
    return I.PIXEL_STAGES[kind](image, options, RNG())


DOT = grey([[255] * 5, [255] * 5, [255, 255, 0, 255, 255], [255] * 5, [255] * 5])


def test_blur():
    flat = grey([[77] * 6] * 4)
    for o in ({"sigma": 2.0}, {"filter": "motion", "motion_length_px": 5}, {"filter": "defocus", "sigma": 2}):
        assert (stage("blur", flat, **o) == flat).all()
    box = plane(stage("blur", DOT, filter="defocus", sigma=1))
    assert [r[1:4] for r in box[1:4]] == [[227] * 3] * 3 and box[0] == [255] * 5  # a ninth of the dot each: 255 * 8 / 9
    assert plane(stage("blur", DOT, filter="motion", motion_length_px=3))[2] == [255, 170, 170, 170, 255]
    assert [r[2] for r in plane(stage("blur", DOT, filter="motion", motion_length_px=3, motion_angle_deg=90))] == [255, 170, 170, 170, 255]
    soft = np.array(plane(stage("blur", DOT, sigma=0.7)))
    assert (soft == soft.T).all() and soft[2, 2] < soft[2, 1] < soft[1, 1] < 255 and abs((255 - soft.astype(int)).sum() - 255) <= 6
    assert (stage("blur", DOT, sigma=0) == DOT).all()
    with pytest.raises(I.StageError):
        stage("blur", DOT, filter="none such")


def test_ink_spreads_and_thins():
    cross = plane(stage("ink_bleed", DOT, kernel_size_px=1))
    assert cross == [[255] * 5, *[[255, 0, 0, 0, 255]] * 3, [255] * 5]
    assert plane(stage("ink_bleed", DOT, kernel_size_px=1, iterations=2)) == [[0] * 5] * 5
    assert plane(stage("ink_thin", grey(cross), kernel_size_px=1)) == plane(DOT)
    assert plane(stage("ink_thin", DOT, kernel_size_px=1)) == [[255] * 5] * 5
    assert (stage("ink_bleed", DOT, iterations=0) == DOT).all()


def test_brightness_contrast_gamma():
    g = grey([[0, 50, 100], [150, 200, 250]])
    assert plane(stage("brightness", g, factor=1.5)) == [[0, 75, 150], [225, 255, 255]]
    assert plane(stage("contrast", g, factor=2.0)) == [[0, 0, 75], [175, 255, 255]]  # the mean is 125
    assert plane(stage("contrast", g, factor=0)) == [[125] * 3] * 2
    assert plane(stage("gamma", g, gamma=2.0)) == [[round(255 * math.sqrt(v / 255)) for v in row] for row in ([0, 50, 100], [150, 200, 250])]
    for kind, key in (("brightness", "factor"), ("contrast", "factor"), ("gamma", "gamma")):
        assert (stage(kind, g, **{key: 1.0}) == g).all()


def test_grayscale():
    px = np.array([[[10, 100, 200]]], np.uint8)
    want = {"luminosity": round(2.99 + 58.7 + 22.8), "average": 103, "red": 10, "green": 100, "blue": 200}
    assert {m: stage("grayscale", px, method=m)[0, 0].tolist() for m in want} == {m: [v] * 3 for m, v in want.items()}
    with pytest.raises(I.StageError):
        stage("grayscale", px, method="none such")


def test_noise():
    flat = grey([[128] * 80] * 80)
    for kind, o, spread in (("gaussian", {"stddev": 10.0}, 10), ("poisson", {}, math.sqrt(128)), ("speckle", {"stddev": 25.5}, 12.8)):
        got = stage("noise", flat, noise_kind=kind, **o).astype(float)
        assert abs(got.mean() - 128) < 1 and abs(got.std() - spread) < 0.05 * spread
    salt = stage("noise", flat, noise_kind="salt_pepper", amount=0.2)
    assert set(np.unique(salt)) == {0, 128, 255} and abs((salt[..., 0] != 128).mean() - 0.2) < 0.03
    assert (stage("noise", flat) == stage("noise", flat)).all() and (stage("noise", flat, stddev=0.0) == flat).all()


@pytest.mark.parametrize("mode,want", [("multiply", [26, 100, 174]), ("screen", [153, 228, 248]), ("overlay", [51, 200, 241])])
def test_blending(mode, want):
    base, top = grey([[51, 128, 222]]), grey([[128, 200, 200]])
    a, b = base[0, :, 0] / 255, top[0, :, 0] / 255
    formula = {"multiply": a * b, "screen": 1 - (1 - a) * (1 - b), "overlay": [2 * x * y if x <= 0.5 else 1 - 2 * (1 - x) * (1 - y) for x, y in zip(a, b)]}[mode]
    got = I._byte(I.blend_images(mode, base, top))[0, :, 0]
    assert got.tolist() == [round(255 * x) for x in formula] and np.abs(got.astype(int) - want).max() <= 2
    assert I._byte(I.blend_images("hard_light", base, top)).tolist() == I._byte(I.blend_images("overlay", top, base)).tolist()


def test_paper_texture():
    page, paper = grey([[255, 100], [50, 0]]), grey([[200, 100], [50, 255]])
    draw = lambda **o: plane(stage("paper_texture", page, textures=[paper], **o))
    assert draw(opacity=1.0) == [[200, 39], [10, 0]]
    assert draw(opacity=0.5) == [[228, 70], [30, 0]]
    assert draw(opacity=0) == plane(page)
    tiles = plane(I.paper_texture(grey([[255] * 5] * 3), {"textures": [paper], "opacity": 1.0}, RNG()))
    assert tiles == [[200, 100, 200, 100, 200], [50, 255, 50, 255, 50], [200, 100, 200, 100, 200]]
    ramp = grey([[v for v in range(60)]] * 60)
    cut = np.array(plane(I.paper_texture(grey([[255] * 7] * 7), {"textures": [ramp], "opacity": 1.0}, RNG())))
    assert (np.diff(cut, axis=1) == 1).all() and (np.diff(cut, axis=0) == 0).all()  # a cut, not a tiling
    assert plane(I.resized(grey([[0, 100], [100, 200]]), 1, 1)) == [[100]] and plane(I.resized(grey([[7]]), 3, 2)) == [[7] * 3] * 2
    turned = I.paper_texture(grey([[255] * 20] * 20), {"textures": [grey([[90] * 60] * 60)], "opacity": 1.0, "rotate_deg": 90}, RNG())
    assert plane(turned) == [[90] * 20] * 20
    with pytest.raises(I.StageError):
        stage("paper_texture", page, textures=[paper], blend="none such")


def test_foxing():
    page = grey([[255] * 40] * 40)
    assert (stage("foxing", page, count=0) == page).all()
    spots = stage("foxing", page, count=3, radius_px=8, opacity=1.0, color=[120, 60, 30]).astype(int)
    assert (spots <= 255).all() and spots.min(axis=(0, 1)).tolist() >= [120, 60, 30] and (spots != 255).any()
    shade = (255 - spots[..., 0]) / 135
    assert np.allclose((255 - spots[..., 2]) / 225, shade, atol=0.01)  # one colour, more or less of it


def test_jpeg_and_webp_loss():
    flat = grey([[128] * 16] * 16)
    assert (stage("jpeg", flat, quality=10, chroma_subsampling="4:2:0") == flat).all() and (stage("webp", flat, quality=10) == flat).all()
    rng = np.random.default_rng(0)
    x = np.clip(rng.normal(128, 40, (33, 47, 3)), 0, 255).astype(np.uint8)
    loss = {q: np.abs(stage("jpeg", x, quality=q, chroma_subsampling="4:4:4").astype(int) - x).mean() for q in (100, 75, 20)}
    assert loss[100] < 1 < loss[75] < loss[20]
    step = grey([[0] * 8 + [255] * 8] * 16)  # an edge on the blocks' border: each block is flat
    assert np.abs(stage("jpeg", step, quality=100, chroma_subsampling="4:4:4").astype(int) - step).max() <= 1
    with pytest.raises(I.StageError):
        stage("jpeg", flat, chroma_subsampling="5:5:5")


def test_skew_turns_image_and_boxes():
    image = grey([[255] * 9] * 5)
    image[2, 6] = 0
    sample = {"image": image, "background": (255, 255, 255), "bbox": (6, 2, 7, 3), "glyphs": [(0, (6, 2, 7, 3))], "words": [("w", (6, 2, 7, 3))], "lines": [], "paragraphs": []}
    out = I.skew(sample, {"angle_deg": 90}, RNG())
    assert out["image"].shape == (9, 5, 3)
    y, x = np.argwhere(out["image"][..., 0] == 0)[0].tolist()
    assert out["bbox"] == (x, y, x + 1, y + 1) == out["words"][0][1] == out["glyphs"][0][1] == (2, 2, 3, 3)
    half = I.skew(sample, {"angle_deg": 180}, RNG())
    assert plane(half["image"])[2][2] == 0 and half["bbox"] == (2, 2, 3, 3)
    assert I.skew(sample, {"angle_deg": 0}, RNG()) is sample


def test_degrade_draws_once_a_stage():
    sample = {"image": grey([[10, 20]])}
    stages = [{"kind": "brightness", "factor": 2.0, "probability": 0.5}] * 40
    powers = [int(np.log2(I.degrade(sample, [s], np.random.Generator(np.random.PCG64(k)))["image"][0, 0, 0] // 10)) for k, s in enumerate(stages)]
    want = [int(np.random.Generator(np.random.PCG64(k)).random() < 0.5) for k in range(40)]
    assert powers == want
    assert (I.degrade(sample, [{"kind": "brightness", "factor": 2.0, "probability": 0.0}], RNG())["image"] == sample["image"]).all()


def test_outlines_cover_what_they_enclose():
    square = [np.array([[0, 0], [1000, 0], [1000, 1000], [0, 1000]], float)]
    cover, left, top = I.rasterize(square, 0.01)
    assert top == -10
    assert cover.shape == (10, 10) and (cover == 1).all() and left == 0 and V.union([(1, 2, 3, 4), (0, 3, 2, 9)]) == (0, 2, 3, 9)


def test_drawn_numbers():
    rng = RNG()
    assert I._number(3, rng) == 3 and I._number({"choices": [{"value": 5, "weight": 0}, {"value": 7}]}, rng) == 7
    whole = {I._number({"min": 1, "max": 3}, rng) for _ in range(200)}
    assert whole == {1, 2, 3} and all(isinstance(x, int) for x in whole)
    broken = [I._number([0.5, 1.5], rng) for _ in range(200)]
    assert 0.5 <= min(broken) < 0.6 and 1.4 < max(broken) <= 1.5
    nested = {I._number({"choices": [{"value": [1, 2]}, {"value": 9}]}, rng) for _ in range(200)}
    assert nested == {1, 2, 9} and I._number({"choices": [{"value": 4, "weight": -1}]}, rng) == 4
