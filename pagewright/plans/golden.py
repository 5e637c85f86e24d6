"""Snippets of markup with the findings they must give, by family.

A query of a family lays snippet page_id % n under each page's id, so that its SQL can say the
findings from the same id.
"""

from __future__ import annotations

FAMILIES: dict[str, tuple[str, list[tuple[str, list[str]]]]] = {
    "images": ("alt_text", [
        ('<img src="a.png">', ["missing-alt-text"]),
        ('<img src="a.png" alt="">', ["empty-alt-text"]),
        ('<img src="a.png" alt=" " role="presentation">', ["compliant-decorative-image"]),
        ('<img src="a.png" alt="" aria-hidden="true">', ["compliant-decorative-image"]),
        ('<img src="a.png" alt="Photo"><img src="b.png" alt="icon">', ["generic-alt-text", "generic-alt-text"]),
        ('<img src="a.png" alt="A red bridge">', ["compliant-alt-text"]),
        ("<p>none</p>", []),
    ]),
    "figures": ("figure_structure", [
        ("<figure><img alt='x'></figure>", ["missing-figure-caption"]),
        ("<figure><figcaption> </figcaption></figure>", ["empty-figure-caption"]),
        ("<figure><figcaption>Fig</figcaption></figure>", ["compliant-figure-structure"]),
        ("<figure><figure><figcaption>In</figcaption></figure></figure>", ["compliant-figure-structure", "compliant-figure-structure"]),
    ]),
    "links": ("link_text", [
        ('<a href="#">x</a>', []),
        ('<a href="#top">Top of page</a>', ["compliant-link-text"]),
        ('<a href="/a"></a>', ["empty-link-text"]),
        ('<a href="/a"><img alt="Home"></a>', ["compliant-image-link"]),
        ('<a href="/a"><img></a>', ["empty-link-text"]),
        ('<a href="/a">Click here</a>', ["generic-link-text"]),
        ('<a href="/a">www.site.test</a><a href="/b">see site.com/x</a>', ["url-as-link-text", "url-as-link-text"]),
        ('<a href="/a">News</a><a href="/b">news</a>', ["compliant-link-text", "compliant-link-text", "duplicate-link-text-different-url", "duplicate-link-text-different-url"]),
        ('<a href="/a"><b>News</b></a><a href="/b"> News</a>', ["compliant-link-text", "compliant-link-text", "duplicate-link-text-different-url"]),
    ]),
    "new_windows": ("new_window", [
        ('<a href="/a" target="_blank">Site</a>', ["new-window-link-no-warning"]),
        ('<a href="/a" target="_blank">Site (new tab)</a>', ["compliant-new-window-link"]),
        ('<a href="/a" target="_blank" aria-label="Site, opens in new window">Site</a>', ["compliant-new-window-link"]),
        ('<a href="/a" target="_blank" title="external site">Site</a>', ["compliant-new-window-link"]),
        ('<a href="/a" target="_blank">Site<span class="sr-only"> new window</span></a>', ["compliant-new-window-link"]),
        ('<a href="/a" target="_blank">Site<i class="fa-external-link"></i></a>', ["compliant-new-window-link"]),
        ('<a href="/a" rel="nofollow external">Site</a>', ["new-window-link-no-warning"]),
        ('<a href="/a" rel="external" target="_blank">Site</a>', ["new-window-link-no-warning", "new-window-link-no-warning"]),
    ]),
    "table_headers": ("table_headers", [
        ('<table role="presentation"><tr><td>1<td>2</tr></table>', []),
        ('<table class="my-Layout"><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>', []),
        ("<table><tr><td>1</td><td>2</td></tr></table>", []),
        ("<table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>", ["table-missing-headers"]),
        ("<table><tr><th>1</th><th scope='col'>2</th></tr><tr><td>3</td><td>4</td></tr></table>", ["table-missing-scope"]),
        ("<table><tr><th scope='col' colspan='2'>1</th></tr><tr><td>3</td><td>4</td></tr></table>", ["table-missing-caption"]),
        ("<table><caption>c</caption><tr><th scope='col' rowspan='3'>1</th></tr><tr><td>3</td></tr></table>", []),
        ("<table><tr><th scope='row'>1</th><td>2</td></tr><tr><th scope='row'>3</th><td>4</td></tr></table>", ["table-missing-caption"]),
    ]),
    "table_structure": ("table_structure", [
        ("<table><thead><tr><th>1</th><th>2</th></tr></thead><tbody><tr><td>3</td><td>4</td></tr></tbody></table>", ["table-irregular-headers"]),
        ("<table><tr><th>1</th><th>2</th></tr><tr><td>3</td><td>4</td></tr></table>", ["table-irregular-headers", "table-missing-tbody", "table-missing-thead"]),
        ("<table><thead><tr><th>1</th><td>2</td></tr></thead><tbody><tr><td>3</td><td>4</td></tr></tbody></table>", ["table-irregular-headers", "table-irregular-headers"]),
        ("<table><thead><tr><th colspan='2'>1</th></tr></thead><tbody><tr><td>3</td><td>4</td></tr></tbody></table>", ["table-irregular-headers", "table-missing-headers-id"]),
        ("<table><thead><tr><th colspan='2' id='h'>1</th></tr></thead><tbody><tr><th>3</th><td>4</td></tr></tbody></table>", []),
    ]),
    "contrast": ("color_contrast", [
        ('<p style="color: #777777">x</p>', ["insufficient-color-contrast"]),
        ('<p style="color: #767676">x</p>', []),
        ('<h1 style="color:#888">x</h1>', []),
        ('<p style="color: rgb(200, 200, 200)">x</p>', ["insufficient-color-contrast"]),
        ('<div style="background-color: #000"><p>x</p></div>', ["insufficient-color-contrast", "insufficient-color-contrast"]),
        ('<p style="color:#888; font-size: 24px">x</p>', []),
        ('<p style="color:#888; font-size: 14pt; font-weight: bold">x</p>', ["insufficient-color-contrast"]),
        ('<p style="color:#888; font-size: 19px; font-weight: bold">x</p>', []),
        ('<p style="color:#888; font-size: 2em">x</p>', []),
        ('<p style="color:#1234">x</p><p style="color:#eee">y</p>', []),
        ('<p style="color:#eee">y</p><p style="color:#1234">x</p>', ["insufficient-color-contrast"]),
        ('<p style="color:#eee"> </p>', []),
    ]),
    "form_labels": ("form_label", [
        ('<input type="hidden"><input type="submit">', []),
        ('<input name="a">', ["form-control-missing-label"]),
        ('<label for="a">A</label><input id="a" name="a">', []),
        ('<label>A <input name="a"></label>', []),
        ('<b id="q">Q</b><input name="a" aria-labelledby="z q">', []),
        ('<b id="q"></b><input name="a" aria-labelledby="q">', ["form-control-missing-label"]),
        ('<input name="a" aria-label="A"><select name="b" title="B"></select>', []),
        ('<textarea placeholder="t"></textarea>', ["form-control-missing-label", "form-control-missing-name"]),
        ('<label for="a"></label><input id="a" name="a">', ["form-label-empty"]),
    ]),
    "form_required": ("form_required", [
        ('<label for="a">A *</label><input id="a" required aria-required="true">', []),
        ('<label for="a">A (Required)</label><input id="a" required>', ["form-required-field-missing-aria"]),
        ('<label>A <input aria-required="true"></label>', ["form-required-field-not-indicated"]),
        ("<textarea required></textarea>", ["form-required-field-missing-aria", "form-required-field-not-indicated"]),
        ('<input type="submit" required>', []),
    ]),
    "form_groups": ("form_fieldset", [
        ("<fieldset><input></fieldset>", ["form-fieldset-missing-legend"]),
        ("<fieldset><legend>L</legend></fieldset>", []),
        ('<form><input type="radio" name="r"><input type="radio" name="r"></form>', ["form-related-controls-no-fieldset"]),
        ('<form><fieldset><legend>L</legend><input type="radio" name="r"></fieldset><input type="radio" name="r"></form>', []),
        ('<form><input type="radio" name="r"><input type="radio" name="s"></form>', []),
        ('<form><input type="checkbox"><input type="checkbox"></form>', []),
        ('<form><input type="checkbox"><input type="checkbox"><input type="checkbox"></form>', ["form-related-controls-no-fieldset"]),
        ('<form><div><div><div><div><input type="checkbox"><input type="checkbox"></div></div></div></div><p><p><p><p><input type="checkbox"><input type="checkbox"></p></p></p></p></form>', ["form-related-controls-no-fieldset", "form-related-controls-no-fieldset"]),
    ]),
    "heading_order": ("heading_hierarchy", [
        ("<p>x</p>", ["no-headings"]),
        ("<h2>x</h2>", ["no-h1"]),
        ("<h1>x</h1><h3>y</h3>", ["skipped-heading-level"]),
        ("<h2>x</h2><h1>y</h1>", ["compliant-heading-hierarchy"]),
        ("<h2>x</h2><h4>x</h4><h6>x</h6>", ["no-h1", "skipped-heading-level", "skipped-heading-level"]),
    ]),
    "heading_texts": ("heading_content", [
        ("<h1></h1><h2>Title</h2>", ["empty-heading", "generic-heading"]),
        ("<h2>One</h2><h1>Two</h1>", ["compliant-heading-content"]),
        ("<p>x</p>", []),
    ]),
    "titles": ("document_title", [
        ("<p>x</p>", ["missing-title"]),
        ("<title></title>", ["empty-title"]),
        ("<title>Untitled</title>", ["generic-title"]),
        ("<title>A report</title>", ["compliant-document-title"]),
    ]),
    "languages": ("document_language", [
        ("<p>x</p>", []),
        ("<html><p>x</p></html>", ["missing-document-language"]),
        ('<html lang="e"></html>', ["invalid-document-language"]),
        ('<html lang="en"></html>', ["compliant-document-language"]),
    ]),
    "landmarks": ("landmarks", [
        ("<nav></nav><div role='banner'></div>", ["compliant-header-landmark", "compliant-navigation-landmark", "missing-footer-landmark"]),
        ("<div role='navigation'></div><footer></footer>", ["compliant-footer-landmark", "compliant-navigation-landmark", "missing-header-landmark"]),
    ]),
    "mains": ("main_landmark", [("<main></main>", ["compliant-main-landmark"]), ("<div role='main'></div>", ["compliant-main-landmark"]), ("<div role='Main'></div>", ["missing-main-landmark"])]),
    "skips": ("skip_link", [
        ('<a href="#m">Skip</a>', ["compliant-skip-link"]),
        ('<a href="/m">Skip</a>', ["missing-skip-link"]),
        ("<a href='/1'>1</a><a href='/2'>2</a><a href='/3'>3</a><a href='/4'>4</a><a href='/5'>5</a><a href='#m'>Skip</a>", ["missing-skip-link"]),
        ("", ["missing-skip-link"]),
    ]),
}
